"""Operators for preparing training text: rules, de-duplication, fingerprints, mixing and tokens.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. The functions take a frame of documents and the
names of its id and text columns; they read no other column, so further columns may have any name and type.
"""
