"""Sources: raw delimited files, archives, manifests and the demo frame."""
