"""Domain parameters.

FIXED VALUES — these must equal the modelled system's settings for results to line up:
feed symbols, risk limits, starting cash, strategy parameters, model settings, periods.
"""

from __future__ import annotations

# --- fixed values: feed -------------------------------------------------------------------
SYMBOLS_RAW = ["BINANCE:ETHUSDT", "BINANCE:BTCUSDT", "BINANCE:SOLUSDT", "BINANCE:ADAUSDT", "BINANCE:XRPUSDT"]
SYMBOL_PREFIX = "BINANCE:"
SYMBOL_SUFFIX = "USDT"
TICKER_PATTERN = "BINANCE:(.*)USDT"
WATCHDOG_TIMEOUT_S = 90
HEARTBEAT_S = 60

# --- fixed values: risk limits and portfolio ----------------------------------------------
MAX_DRAWDOWN = 0.5
MAX_ALLOCATION = 0.5
MAX_SHORT = 200000.0
STARTING_CASH = 200000.0
SNAPSHOT_PERIOD_S = 300
LONG_ONLY = "Long Only"
LONG_ONLY_BUFFER = 0.999999999
EPS = 1e-8

# --- fixed values: confidence → size factor ------------------------------------------------
CONF_HIGH, CONF_MID = 0.7, 0.55
SIZE_HIGH, SIZE_MID, SIZE_LOW = 1.0, 0.5, 0.25

# --- fixed values: strategies (name, description, execution period s, allocation, reset s, max streak)
STRATEGIES = [
    ("Long Only", "Buy and hold benchmark strategy.", 86400, 1.0, 86400, 0),
    ("Random_Forest", "Ensemble of decision trees that captures non-linear relationships.", 240, 0.4, 14400, 8),
    ("Gradient_Boosting", "Sequentially builds an ensemble to reduce errors and improve accuracy.", 360, 0.4, 14400, 7),
    ("Logistic_Regression", "A linear baseline model for classification tasks.", 120, 0.45, 43200, 8),
    ("LSTM", "Captures temporal dependencies and sequential patterns in data.", 900, 0.5, 43200, 5),
    ("SVM", "Separates classes using non-linear decision boundaries.", 600, 0.35, 43200, 6),
]

# --- fixed values: the model each strategy reads its signals from (model names carry the ticker behind them)
STRATEGY_MODELS = {
    "Random_Forest": "Random-Forest",
    "Gradient_Boosting": "Gradient-Boosting",
    "Logistic_Regression": "Logistic-Regression",
    "LSTM": "LSTM",
    "SVM": "SVM-(RBF-Kernel)",
}
MODEL_TICKER = "ETH"

# --- fixed values: portfolios present before any trade (strategy, ticker)
SEED_PORTFOLIOS = [
    ("Long Only", "ETH"), ("Long Only", "BTC"), ("Long Only", "XRP"), ("Long Only", "ADA"), ("Long Only", "SOL"),
    ("Random_Forest", "ETH"), ("Gradient_Boosting", "ETH"), ("Logistic_Regression", "ETH"), ("LSTM", "ETH"), ("SVM", "ETH"),
]

# --- fixed values: texts of failed checks
MSG_POSITION = "Trade value %.2f exceeds max allocation %.1f%% of portfolio %.2f."
MSG_CASH = "Not enough cash. Needed %.2f, available %.2f."
MSG_SHORT = "Short position limit exceeded. Current %s, attempted trade %s"
MSG_DRAWDOWN = "Max drawdown %.2f%% exceeded limit %.0f%%."
ERR_POSITION = "Error in position size check."
ERR_CASH = "Error in cash balance check."
ERR_QUANTITY = "Error in quantity balance check."
ERR_DRAWDOWN = "Error in drawdown check."

# --- fixed values: models (name, description, retrain hours) --------------------------------
MODELS = [
    ("Logistic-Regression", "A linear baseline model for classification tasks.", 4),
    ("Gradient-Boosting", "Sequentially builds an ensemble to reduce errors and improve accuracy.", 12),
    ("Random-Forest", "Ensemble of decision trees that captures non-linear relationships.", 6),
    ("SVM-(RBF-Kernel)", "Separates classes using non-linear decision boundaries.", 12),
    ("LSTM", "Captures temporal dependencies and sequential patterns in data.", 24),
]

# --- fixed values: features and labels -----------------------------------------------------
LABEL_HORIZON = 60
BUY_Q, SELL_Q = 0.7, 0.3
MIN_CLASS_RATIO = 0.1
MIN_TRAIN_ROWS = 1440
SERVING_LOOKBACK_H = 2
SERVING_BARS = 120
TEST_FRACTION = 0.2
SELL, HOLD, BUY = 0, 1, 2
