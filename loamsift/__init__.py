"""loamsift: Spark-native curation of web-text corpora for language-model pretraining."""

__version__ = "0.1.0"
