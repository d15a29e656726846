"""Slides, manifests and events in; masks, images, manifests and summaries out."""
