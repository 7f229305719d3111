"""Column-level building blocks: ``Column -> Column`` functions with no shuffle of their own."""
