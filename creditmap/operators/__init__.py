"""Generic relational operators: versioned hops, interval joins, owner
ranking, snapshot selection, runtime filters, skewed joins, conform / accumulate."""
