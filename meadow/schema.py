"""Column contracts shared by every operator.

abundance     sample_id, feature_id, count (> 0; an absent pair means 0)
sample_meta   sample_id + free columns
feature_meta  feature_id, taxonomy, optional ranks and sequence
branch        branch_id, feature_id, length (one row per branch and leaf below it)
pairs         a, b, d with a < b
edges         src, dst, weight
"""

SAMPLE = "sample_id"
FEATURE = "feature_id"
COUNT = "count"

RANKS = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]

# Spellings of a missing value in free text metadata.
NULL_TOKENS = [
    "nan", "NAN", "NaN", "Null", "null", "None", "none", "", " ", "Missing", "missing", "na", "NA", "unknown",
]

# Spellings of a missing rank label.
EMPTY_RANKS = ["nan", "NaN", "None", "", "<NA>", "NoneType"]
