"""Spark-native cleaning, profiling, modelling and scoring of priced listings."""
