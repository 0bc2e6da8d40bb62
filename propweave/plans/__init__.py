"""Rule programs and lineage cutting."""
