"""Stage plans and the two end-to-end attributions."""
