"""Audience estimation operators for Spark: lazy DataFrame -> DataFrame functions."""
