"""DataFrame operators: context, rendering, tokenising, batching, generation, scoring."""
