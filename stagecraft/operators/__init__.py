"""Relational operators of the staging job, each a ``DataFrame -> DataFrame`` function.

``timeline``    observed-date spine per loan and gap fill
``events``      rolling DPD statistics, event flags, imputed rows, last NPL date
``npl``         NPL date reset for restructured loans
``runs``        stage-2 runs (gaps and islands)
``milestones``  first/last event after an anchor, chained per loan
``classify``    the three stage decision tables and the published months
"""
