"""Column functions: text, names, dates, urls and nulls. All are expressions unless they say otherwise."""
