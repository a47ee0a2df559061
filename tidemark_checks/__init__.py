"""Queries over the test tables with independent SQL, and the clinical tables derived for them."""
