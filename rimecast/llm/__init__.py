"""Training-data operators: each module holds one operator with a general interface.

``queries`` derives the registered ``opN_*`` results from them. Nothing outside
this folder (and ``corpus_pipeline.py``) imports it.
"""
