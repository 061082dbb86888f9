"""Landing directories, shared file systems and the catalog."""
