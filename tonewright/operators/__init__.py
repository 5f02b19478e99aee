"""DataFrame -> DataFrame operators: sampling, TF-IDF, classifiers, voting."""
