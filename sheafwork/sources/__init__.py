"""Readers: tab-separated catalogues, id lists, metadata bundles, file listings, images."""
