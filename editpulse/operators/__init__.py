"""DataFrame-in, DataFrame-out operators of the star schema and its maintenance."""
