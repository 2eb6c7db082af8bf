"""Values that results depend on, kept in one place.

Everything here equals the source workflow's choice; functions take them as
defaults, so a caller can pass other values.
"""

# Category labels, sentinels and thresholds of the credit data.
XNA = "XNA"
DAYS_EMPLOYED_SENTINEL = 365243
PREV_STATUSES = {"Approved": "approved", "Refused": "refused", "Canceled": "canceled", "Unused offer": "unused"}
PREV_TYPES = {"Consumer loans": "consumerloans", "Cash loans": "cashloans", "Revolving loans": "revolvingloans"}
PREV_APPROVED_COLS = ("NAME_CONTRACT_TYPE", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
                      "NAME_YIELD_GROUP", "NFLAG_INSURED_ON_APPROVAL", "RATE_INTEREST_PRIMARY",
                      "RATE_INTEREST_PRIVILEGED")
CREDIT_TYPES = {"Mortgage": "mortgage", "Real estate loan": "realestate", "Car loan": "carloan",
                "Loan for business development": "loanbusiness",
                "Loan for the purchase of equipment": "loanpurchase",
                "Cash loan (non-earmarked)": "cashloan",
                "Loan for working capital replenishment": "workingloan"}
CREDIT_CARD = "Credit card"
CREDIT_ACTIVE_MAP = {"Closed": 0, "Active": 1}
DEFAULT_DAYS = 270
BALANCE_USAGE = 0.8
PCT_CHANGE_CAP = 30
STATUS_OPEN, STATUS_LATE = "0", "1"
STATUS_LEVELS = ("0", "1", "2", "3", "4", "5")
STATUS_EXCLUDED = ("X", "C")
N_LATEST = 4

# Preparation, splitting, sequence and evaluation defaults.
STRING_FILL = "Not_Applicable"
CLUSTER_STRING_FILL = "NA"
MISSING_CODE_LABEL = "nan"
CORR_THRESHOLD = 0.98
TEST_SIZE = 0.05
SEED = 1234
N_FOLDS = 5
SEQ_ROWS = 5
SEQ_PAD = -99.0
SEQ_FEATURES = 100
SEQ_PREFIX = "bfeat_"
SCORE_THRESHOLD = 0.1
RESAMPLED_THRESHOLD = 0.5
PCA_COMPONENTS = 150

# The boosted-tree search grid of the source (learning rate,
# depth, minimum child weight, minimum gain, column share per tree) and the hidden layer
# sizes of its fully connected network.
GBT_GRID = {
    "stepSize": [0.05, 0.1, 0.15, 0.2],
    "maxDepth": [3, 4, 5, 6, 8, 10],
    "minInstancesPerNode": [1, 3, 5, 7],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3, 0.4],
    "featureSubsetStrategy": ["0.5", "0.7", "1.0"],
}
# The parameters that the source found for its leaf-wise learner.
LEAFWISE_PRESET = {
    "col_share": 0.45544541538547634,
    "learning_rate": 0.09712737568777673,
    "max_depth": 10,
    "min_child_weight": 44.81416318834993,
    "min_split_gain": 0.47913323843650946,
    "num_leaves": 44,
    "reg_alpha": 8.507126649843658,
    "reg_lambda": 2.2113739093853257,
    "row_share": 0.43342993037373423,
}
MLP_HIDDEN = (150, 75, 25)
