"""Texts that several tests use."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "s", "ed", "ing", ".")) for _ in range(n))


LONG = prose(1, 30_000)
