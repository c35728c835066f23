"""Input feeds (files, fixture views) and the table layout."""
