"""lexmill: corpus statistics as Spark DataFrame transformations.

Word counts, co-occurrence within a distance, document frequency, top terms and
TF-IDF. Every operator takes and returns a lazy DataFrame.
"""
