"""DataFrame operators: cleansing (``clean``), reshape/dedupe (``reshape``), returns
(``returns``), as-of joins (``asof``), mutation (``mutate``), versions (``versions``),
incremental loads (``incremental``), data tests (``quality``) and set/sort helpers
(``setops``)."""
