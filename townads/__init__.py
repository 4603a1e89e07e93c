"""Spark jobs over streams of classified ads: extraction, cleaning, windowed counts, roll-ups."""
