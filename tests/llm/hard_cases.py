"""Parts of the hard cases that several tests use."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns carry names that the operators use inside.
EXTRA = (
    ", salt int, node string, row_mark string, text_sha256 string, kept boolean, toxic_flag boolean, "
    "capacity int, weight int, place string, block int, root string, score double, host string"
)
EXTRA_CELLS = (1, "n", "m", "h", True, False, 2, 3, "p", 4, "r", 0.5, "q")


def words(rng, n, size=400):
    return " ".join("w%d" % rng.randrange(size) for _ in range(n))
