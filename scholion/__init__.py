"""Scholion: structured records from scientific papers, as Spark DataFrame jobs."""
