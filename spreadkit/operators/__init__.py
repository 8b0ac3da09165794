"""DataFrame -> DataFrame operators: counts, words, distances, centers, diversity."""
