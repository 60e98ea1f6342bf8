"""DataFrame-to-DataFrame operators. None of them reads, writes or collects a data path."""
