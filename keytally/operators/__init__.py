"""DataFrame -> DataFrame operators: counting, offsets, running sums, generators."""
