"""Training-data operators: chat formatting, deduplication, filters, decontamination and packing.

Nothing outside this folder imports it.  ``registry`` lists its queries and their SQL.
"""
