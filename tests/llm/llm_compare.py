"""Helpers of these tests."""

WORDS = (
    "the of and river house stone light water green token secret quick brown little mountain "
    "window garden letter number morning evening story paper table winter summer bridge forest"
).split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def as_bag(rows):
    """Rows as a sorted list, whatever their order."""
    return sorted((tuple(r) for r in rows), key=repr)
