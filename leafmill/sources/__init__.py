"""leafmill.sources"""
