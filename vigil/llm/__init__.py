"""Training-data operators: formatting, search, packing, scoring, dedup, PII.

Nothing outside this package imports it. Python that runs in tasks lives in
these modules, so a cluster must be given the package (``--py-files``).
"""
