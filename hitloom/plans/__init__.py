"""Topic specs and the bronze, silver and gold jobs that run them."""
