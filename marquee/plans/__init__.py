"""Report tables and the dashboard and admin queries built on them."""
