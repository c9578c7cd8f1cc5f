"""leafmill.operators"""
