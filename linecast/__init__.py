"""linecast: Spark-native prediction of sports betting lines.

Resolves player names to ids, joins every offered line to the player's
game-by-game history, predicts the value (plain mean or a recency-weighted,
seeded, distributed scenario simulation), turns predictions into over/under
recommendations, appends them idempotently and answers the report queries.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins so Catalyst can prune, push down and code-generate the whole plan.
"""

__all__ = ["session", "schemas"]
