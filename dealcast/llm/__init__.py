"""Training-data operators: decontamination, near-duplicates, classifiers,
search, packing, archives, chat rendering and token files.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator plus the corpus pipeline.
"""
