"""What the driver runs: every query over the test tables, and its SQL counterpart."""
