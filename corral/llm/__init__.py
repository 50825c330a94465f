"""Operators for preparing training data: packing, fingerprints, token counts,
token files, similarity joins, toxicity and quality scores, secret scans,
subword encoding and nearest neighbours.  Nothing outside this subpackage
imports it.
"""
