"""End-to-end flows that tie the operators together through stored tables."""
