"""Operators of a training-data pipeline. Nothing else in the package imports from here.

Common rules, which every operator's docstring refers to: operators read the columns
they name and no others, so further columns, whatever they are called, neither change
a result nor appear in it. Repeated rows are rows of their own. An empty table gives
an empty result with the same columns.
"""
