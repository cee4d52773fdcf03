"""Operations of a training-data pipeline: packing, deduplication, scoring, search.

Nothing outside this package imports it.  Each module holds one operator with
its own interface; ``queries`` holds the thin registered queries.

Common rules: null texts count as empty; columns that an operator does not name
are ignored or carried along unchanged; an empty table gives an empty result.
"""
