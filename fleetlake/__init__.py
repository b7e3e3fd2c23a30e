"""Vehicle-rental analytics as Spark jobs: clean, type, check, model, report."""
