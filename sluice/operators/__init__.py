"""DataFrame operators: fields, routing, errors, change streams, order, metrics, user hooks."""
