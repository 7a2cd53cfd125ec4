"""Layer jobs, audit trail, pipeline runs and the registered queries."""
