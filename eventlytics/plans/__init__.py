"""End-to-end plans: the reference's nine jobs and the registered queries."""
