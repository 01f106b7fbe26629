"""DataFrame in, DataFrame out; no reads or writes."""
