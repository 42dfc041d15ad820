"""DataFrame in, DataFrame out: no operator here reads, writes or collects."""
