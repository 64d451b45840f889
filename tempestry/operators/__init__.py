"""DataFrame in, DataFrame out: cleaning, de-duplication, facts, marts, insights, checks."""
