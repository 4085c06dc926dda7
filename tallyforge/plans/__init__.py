"""Report specifications.  Every function takes ``tables`` (name ->
DataFrame, in the report schema) plus literal parameters and returns a lazy
DataFrame; nothing is collected."""
