"""Table operators of the caption pipeline."""
