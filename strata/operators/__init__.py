"""Modelling operators: plain DataFrame -> DataFrame functions."""
