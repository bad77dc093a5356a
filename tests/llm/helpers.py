"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def documents(spark, rows):
    """(doc_id, text) with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", None, i, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_tokens long, keep_id long, norm string")


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, prose(300, 1)), (6, "x" * 3000), (7, "é漢字😀 <s>▁ ok\x00"), (8, "word " * 2000), (None, "lost"), (9, "Á ‍.")]
