"""Training-data operators: each module holds one operator and its general
interface; ``queries`` applies them to the given tables."""
