"""Part of the timeline engine."""
