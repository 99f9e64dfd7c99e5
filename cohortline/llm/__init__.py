"""Operators of a training-data pipeline: repeated-text removal, language
modelling, decontamination, token files, toxicity, near-duplicates, source
mixing, quality and HTML extraction. Nothing outside this package imports it.
"""
