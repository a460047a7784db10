"""Incremental execution of the batch operators.

The study itself is batch-only; the one streaming form offered is the
Silver → strata → stratum count chain over trip files as they land in a
folder (new monthly files), so the population table behind sampling stays
current without re-reading old months.
"""
