"""Whole plans: the caption pipeline from annotated rows to count tables, and the driver's tables as captions."""
