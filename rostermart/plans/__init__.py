"""Star load, measures, trends, pages, access, models and the whole run."""
