"""Reading and writing: snapshots, versioned tables, exports, polite fetching."""
