"""Claims analytics as Spark jobs: landing, quarantine, facts, marts and checks."""
