"""Training-data operators: filtering, de-duplication, mixing, tokenizing, archives.

Nothing else in the library imports this subpackage. Its registered queries
are in ``queries.py``; the pipeline that chains five of the operators is
``corpus_pipeline.py`` at the top of the repository.
"""
