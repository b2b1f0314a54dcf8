"""DataFrame operators over articles, notes and the graph they form."""
