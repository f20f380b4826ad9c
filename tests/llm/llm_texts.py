"""Made texts of the tests."""

PROSE = "the quick brown fox jumps over a lazy dog while seven small birds sing of rivers, hills and rain".split()


def sentence(start: int, n: int) -> str:
    """Words that differ from place to place."""
    return " ".join(f"{PROSE[(start * 7 + i * 5) % len(PROSE)]}{(start * 31 + i) % 97}" for i in range(n))
