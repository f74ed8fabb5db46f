"""Physical-plan helpers (size-checked broadcast) and the publish/run pipeline."""
