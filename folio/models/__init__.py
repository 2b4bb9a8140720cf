"""Classifiers: closed-form naive Bayes, MLlib linear models and their ensembles."""
