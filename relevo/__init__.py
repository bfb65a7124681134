"""relevo: a PySpark-native text relevance engine.

Reads collections of short texts, cleans and tokenises them with built-in
Spark expressions, mines frequent word sets per collection, turns a chosen
word set into weak labels, tunes TF-IDF + logistic regression per collection
and scores every text; summaries are histograms and per-collection shares.
"""

__version__ = "0.1.0"
