"""Document-tree extraction, change detection, review and release as Spark plans."""
