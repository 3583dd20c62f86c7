"""DataFrame operators: postings, statistics, scoring, ranking, features, learners."""
