"""These must stay exactly as they are for results to agree."""

# Forum sources admitted to the corpus.
SOURCES = ("confession", "confessions", "offmychest", "TrueOffMyChest", "tifu", "AmItheAsshole")

# Bodies that mean "the author or a moderator took this down".
REMOVED_BODIES = ("[removed]", "[deleted]")

# Field names of the structured document.
TITLE_FIELD = "title"
BODY_FIELD = "confession"

# Separator of the concatenated duplicate key.
KEY_SEPARATOR = "|||"

# Characters that count as whitespace at the ends of a text.
STRIP_CHARS = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that a CSV reader may take for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Corpus sizes.
MIN_CHARS = 40
MAX_CHARS = 2000
SHARD_ROWS = 10_000
VAL_ROWS = 10_000
SEED = 42

# Tokenizer.
SPLIT_PATTERN = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}"
    r"| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)
SPECIAL_TOKENS = ("<|reserved_0|>", "<|reserved_1|>", "<|reserved_2|>", "<|reserved_3|>")
VOCAB_SIZE = 8192
TOKENIZER_MAX_CHARS = 1_000_000_000
TOKENIZER_DOC_CAP = 10_000

# Training rows and evaluation.
SEQ_LEN = 512
EVAL_TOKENS = 5_242_880
DOC_BATCH = 128
PACK_LEN = 2048
CONTEXT_LENGTHS = (64, 128, 256, 512, 1024, 2048)

# Sampling and display.
SHORT_CHARS = 50
SAMPLE_CHARS = 800
SAMPLE_MARK = "...[truncated]"
LABEL_CHARS = 45
LABEL_KEEP = 42
LABEL_MARK = "..."
LOAD_ROWS = 200_000

# Experiment log.
RESULT_COLUMNS = ("commit", "val_bpb", "memory_gb", "status", "description")
BASELINE_MARGIN = 0.0005
AXIS_MARGIN = 0.15
SUMMARY_KEYS = (
    "val_bpb", "training_seconds", "total_seconds", "peak_vram_mb", "mfu_percent",
    "total_tokens_M", "num_steps", "num_params_M", "depth", "dataset", "train_batch_size",
    "eval_batch_size", "activation_checkpointing", "smoke_test",
)
STEP_PATTERN = (
    r"step (\d+) \(([\d.]+)%\) \| loss: (\S+) \| lrm: ([\d.]+) \| dt: (\d+)ms"
    r" \| tok/sec: ([\d,]+) \| mfu: (\S+) \| epoch: (\d+) \| remaining: (\d+)s"
)
LOSS_LIMIT = 100.0
EMA_BETA = 0.9
WARMUP_STEPS = 10

# Search policies.
START_TEMPERATURE = 0.005
COOLING = 0.97
REHEAT_TEMPERATURE = 0.003
REHEAT_AFTER = 15
POPULATION = 5
