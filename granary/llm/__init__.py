"""Training-data operators; ``registry`` lists their queries. Nothing outside this folder imports it."""
