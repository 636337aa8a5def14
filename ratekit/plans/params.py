"""Parameters shared by the registered Spark queries and their SQL oracle."""

SEED = 42
STRAT_TEST, STRAT_VAL = 0.1, 0.1      # stratified split, validation "of the total"
RAND_TEST, RAND_VAL = 0.1, 0.1        # random split, validation "of the remainder"
BATCH_SIZE = 256
BATCH_EPOCH = 1
SAMPLE_N = 1000
HIST_BINS = 10
QUANTILE_ACCURACY = 1_000_000     # quartiles are exact up to so many rows
HOT_VALUE = 100                   # rows from which a category is joined apart
NOISE_SIGMA = 0.05
LATENT_NORM_WEIGHT = 0.001
HIST_EPOCHS = 20
HIST_PRIOR = 3.0
PATIENCE = 5
LR0 = 0.001
PLATEAU_FACTOR = 0.5
PLATEAU_PATIENCE = 2
PLATEAU_THRESHOLD = 0.0001
