"""Where results go: staging, serving, versioned tables, databases, topics."""
