"""DataFrame operators. They are lazy, but for ``lookup`` and ``rangecount``, which write a small table."""
