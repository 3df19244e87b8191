"""Fixed values.

Results depend on these being exactly as they are: the default candidate tags, the prompt
wording, the thresholds, the split shares and the training settings.
"""

DEFAULT_TAG_CANDIDATES = [
    "風景", "自然", "山", "海", "森", "空",
    "都市", "建物", "道路", "夜景",
    "食べ物", "料理", "フルーツ",
    "スポーツ", "サッカー", "野球",
    "動物", "犬", "猫", "鳥",
    "人物", "グループ", "ポートレート",
]

PROMPT_PREFIX = "This is a photo of "
PROMPT_SUFFIX = "."

TAG_SCORE_THRESHOLD = 0.30
FALLBACK_TAGS = 3
SCORE_DECIMALS = 4

TRAIN_SHARE = 0.70
TRAIN_AND_VALID_SHARE = 0.85
SEED = 42
MIN_CAPTIONS = 2
CATEGORY = "coco"

IMAGE_EXTENSIONS = ["jpg", "jpeg", "png"]
PLACEHOLDER_SIDE = 384
PLACEHOLDER_CHANNELS = 3

NUM_EPOCHS = 5
BATCH_SIZE = 8
LEARNING_RATE = 5e-5
TRAINABLE_LAYERS = ["text_model.head", "vision_model.head"]
LOSS_NAME = "sigmoid_contrastive"

TAGS_DDL = "ARRAY<STRUCT<tag:STRING,score:DOUBLE>>"
METRICS_DDL = (
    "inference_time_ms DOUBLE, gpu_memory_allocated_mb DOUBLE, "
    "gpu_memory_peak_mb DOUBLE, gpu_utilization_pct DOUBLE"
)
