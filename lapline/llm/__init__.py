"""Training-data operators: ten stand-alone corpus operators and their registered queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports from here.
"""
