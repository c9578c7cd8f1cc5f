"""leafmill.streaming"""
