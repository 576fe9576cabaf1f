"""tarnweave: record fusion, entity resolution and relationship analysis on Spark."""
