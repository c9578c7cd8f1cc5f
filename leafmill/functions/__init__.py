"""leafmill.functions"""
