"""The batch jobs as frame-to-frame plans; no I/O inside, apart from ``lake``."""
