"""Sources: file listing/selection and readers for change files, snapshots and stored tables."""
