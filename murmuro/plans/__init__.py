"""Multi-step jobs and the catalog of registered queries."""
