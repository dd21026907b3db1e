"""cardloom: daily card, direct-debit and customer feeds as Spark DataFrame operators.

Every operator takes DataFrames (plus plain configuration values) and returns a
DataFrame.  Nothing runs until a sink in :mod:`cardloom.sources` writes it, so
one run is one Catalyst plan per output table.
"""
