"""Dataflow operators: lazy DataFrame-to-DataFrame functions."""
