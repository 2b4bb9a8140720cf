"""Default parameters of the pipeline."""

# The reference results depend on these numbers.
MIN_BODY_CHARS = 150
MIN_DF = 3
MAX_DF = 0.90
LEGACY_MAX_DF = 0.8
MAX_FEATURES = 50_000
K_BEST = 150
TOP_FEATURES = 20
NB_ALPHA = 0.1
LR_C = 5.0
META_C = 1.0
SVC_C = 1.0
CV_FOLDS = 5
STACKING_FOLDS = 3
SEED = 42
CUTOFF_MONTHS = 3
MIN_TRAIN_ROWS = 50
MIN_TEST_ROWS = 10
PAGE_SIZE = 15
EMBED_BODY_CHARS = 200
EMBED_BATCH = 64
ENCODE_LENGTH = 128
BATCH_SIZE = 32
