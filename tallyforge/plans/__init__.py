"""The retail models: staging, facts, dimensions, aggregates, and their assembly."""
