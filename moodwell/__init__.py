"""Social-post cleaning and emotion analytics as Spark DataFrame functions."""
