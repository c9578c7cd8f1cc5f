"""leafmill: document-archive analytics expressed as Spark plans."""
