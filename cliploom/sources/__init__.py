"""Sources: file listings, manifests, metadata, shard lists, states."""
