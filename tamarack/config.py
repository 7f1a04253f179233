"""Settings of the text-analytics operators, and their word lists."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

# Word lists that results depend on, in their natural order.
CLAUSE_CONNECTORS = (
    "nhưng", "tuy nhiên", "mà", "lại", "còn", "song", "nhiên",
    "vì", "do", "nên", "do đó", "nên", "dẫn đến", "khiến", "làm",
    "để", "cho", "nhằm",
    "nếu", "khi", "khi nào", "trường hợp",
    "dù", "mặc dù", "dù là", "cho dù",
    ";", ":", "—", "–",
)
NEGATION_WORDS = (
    "không", "chẳng", "chả", "đâu", "đâu có", "hông", "hok", "ko", "k", "kh", "chưa",
    "chẳng bao giờ", "không bao giờ", "chẳng có", "không có", "không phải", "chẳng phải",
    "đối lập", "ngược lại", "trái ngược",
)
ASPECT_KEYWORDS = {
    "food": (
        "món ăn", "đồ ăn", "thức ăn", "món", "ngon", "dở", "hợp khẩu vị", "đậm đà", "hương vị", "tươi", "chín", "sống", "nguyên liệu", "nguyên vật liệu", "chất lượng",
        "menu", "thực đơn", "đặc sản",
    ),
    "service": (
        "phục vụ", "nhân viên", "nhân viên phục vụ", "bồi bàn", "thu ngân", "quản lý", "chủ quán", "thái độ", "tư vấn", "hỗ trợ", "giúp đỡ", "yêu cầu", "khiếu nại",
        "giải quyết", "xử lý", "chu đáo", "tận tâm", "hời hợt", "lười biếng", "chậm chạp", "am hiểu", "lễ tân",
    ),
    "ambiance": (
        "không gian", "không khí", "bầu không khí", "phong cách", "kiến trúc", "thiết kế", "trang trí", "đèn", "ánh sáng", "nhạc", "âm nhạc", "đẹp", "xinh", "sang",
        "hiện đại", "cổ điển", "vintage", "retro", "minimal", "mở", "kín", "mái hiên", "sân thượng", "balcony", "view", "cảnh", "hồ", "biển", "sông", "thành phố",
        "bình yên", "ồn ào", "yên tĩnh", "nghỉ ngơi", "chill", "relax", "thư giãn", "stress", "mệt",
    ),
    "cleanliness": (
        "sạch", "vệ sinh", "lau chùi", "quét dọn", "rác", "bẩn", "đuối", "muỗi", "chuột", "gián", "sâu", "bọ", "mùi", "hôi", "thơm", "xà phòng", "cồn", "khử khuẩn",
    ),
    "price": (
        "giá", "giá tiền", "chi phí", "tiền", "đắt", "rẻ", "hời", "bèo", "hợp lý", "vừa phải", "quá đắt", "quá rẻ", "giảm giá", "khuyến mãi", "sale", "đáng tiền",
        "chát", "thanh toán", "trả tiền", "momo", "zalopay", "vietqr", "ngân hàng", "thẻ", "tiền mặt", "qr", "chuyển khoản",
    ),
    "location": (
        "vị trí", "địa chỉ", "đường", "phố", "quận", "huyện", "tp", "thành phố", "xuất phát", "gần", "xa", "gần đây", "khoảng cách", "trung tâm", "bình thường",
        "dễ tìm", "khó tìm",
    ),
    "speed": (
        "nhanh", "chậm", "lâu", "đợi", "chờ", "phục vụ nhanh", "phục vụ chậm", "gọi món", "order", "đặt món", "xuất món", "ra món", "đưa món", "lên món", "thời gian",
        "phút", "giờ", "tiết kiệm", "mất thời gian", "hối lộ", "vip", "ưu tiên", "bình thường", "chờ đợi", "đợi lâu", "đợi một lúc",
    ),
}
NAME_PREFIXES = ("di tích", "bãi biển", "núi", "hồ", "đền", "chùa", "công viên", "khu du lịch")
LABELS = ("negative", "neutral", "positive")
LABEL_NAMES = {"NEG": "negative", "NEGATIVE": "negative", "LABEL_0": "negative", "NEU": "neutral", "NEUTRAL": "neutral", "LABEL_1": "neutral", "POS": "positive", "POSITIVE": "positive", "LABEL_2": "positive"}
REQUIRED_S3 = ("sentence_id", "sentence_text", "sentence_hash", "label", "score", "label_id")
REQUIRED_ABSA = ("record_id", "entity_id", "source", "sentence", "aspect", "sentiment", "confidence_score", "platform", "created_at")


def dictionary(raw: dict[str, tuple[str, ...] | list[str]] = ASPECT_KEYWORDS) -> list[tuple[int, str, str]]:
    """``(order, keyword, aspect)``: keywords stripped and lower-cased, the first aspect that names a keyword has it."""
    out: dict[str, str] = {}
    for aspect, words in raw.items():
        for w in words if isinstance(words, (list, tuple)) else []:
            if w.strip():
                out.setdefault(w.strip().lower(), aspect)
    return [(k, w, a) for k, (w, a) in enumerate(out.items())]


@dataclass(frozen=True)
class TextConfig:
    lowercase: bool = True
    nfc: bool = True
    min_sentence_len: int = 3
    use_clause_split: bool = True
    min_clause_len: int = 5
    connectors: tuple[str, ...] = CLAUSE_CONNECTORS


@dataclass(frozen=True)
class AspectConfig:
    enabled: bool = True
    keywords: tuple[tuple[int, str, str], ...] = field(default_factory=lambda: tuple(dictionary()))
    negators: tuple[str, ...] = NEGATION_WORDS
    protected: tuple[str, ...] = ()  # compounds in which a negator does not negate
    negation_window: int = 4
    strict_boundary: bool = False  # True: a keyword must also end at a word's end
    prefer_longest: bool = False
    keep_unmatched: bool = True
    min_clause_len: int = 3
    min_segment_len: int = 3
    strategy: str = "clause"
    window_before: int = 6
    window_after: int = 6
    include_keyword: bool = True
    dedupe_by_hash: bool = True
    max_per_sentence: int = 0
    granularity: str = "aspect_span"


@dataclass(frozen=True)
class QualityConfig:
    min_score: float = 0.3
    max_score: float = 1.0
    min_len: int = 3
    max_len: int = 512
    labels: tuple[str, ...] = LABELS
    label_distribution_min_pct: float = 0.01
    min_aspect_coverage: float = 0.0
    required_aspects: tuple[str, ...] = ()
    max_aspects_per_sentence: int = 10


@dataclass(frozen=True)
class PipelineConfig:
    text: TextConfig = TextConfig()
    aspects: AspectConfig = field(default_factory=AspectConfig)
    quality: QualityConfig = QualityConfig()
    provider: str = "stub"
    model_dir: str = ""
    model_version: str = "stub"
    batch_size: int = 32
    max_length: int = 256
    output_root: str = "data/sentiment"
    raw_root: str = "data/raw"
    limit: int = 0  # rows that the first stage and the scores of a trial run take; 0: all


def all_aspects(raw: dict = ASPECT_KEYWORDS) -> list[str]:
    return sorted(raw)


def keywords_of(aspect: str, raw: dict = ASPECT_KEYWORDS) -> list[str]:
    """As listed; none for an unknown aspect."""
    return list(raw.get(aspect, ()))


def nested(cfg: dict, path: str, default=None):
    """A value by dotted path; missing and null give the default."""
    for key in path.split("."):
        if not isinstance(cfg, dict) or cfg.get(key) is None:
            return default
        cfg = cfg[key]
    return cfg


def option(cfg: dict, key: str, default):
    """Segment options: the nested ``segment`` block first, then the top level."""
    return nested(cfg, f"segment.{key}", cfg.get(key) if cfg.get(key) is not None else default)


def provider_of(cfg: PipelineConfig) -> str:
    """The environment overrides the setting; providers that load a model need its directory."""
    provider = os.environ.get("SENTIMENT_PROVIDER") or cfg.provider
    if provider != "stub" and not cfg.model_dir:
        raise ValueError("a model directory is needed")
    return provider


def load_yaml(path: str | None, env: str = "PIPELINE_CONFIG", default: str = "") -> dict:
    """Settings from a YAML file: parameter, then environment, then default."""
    import yaml

    at = path or os.environ.get(env) or default
    if not at or not Path(at).exists():
        raise FileNotFoundError(at or "no configuration file")
    return yaml.safe_load(Path(at).read_text(encoding="utf-8")) or {}
