"""End-to-end jobs: index a collection, retrieve, learn and rank."""
