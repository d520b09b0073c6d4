"""The same rules on streams of landed feeds."""
