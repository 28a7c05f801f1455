"""Fixed values of the localization rules: term lists, policy tables, patterns.  Pass others where a rule takes them."""

from __future__ import annotations

# Length policy per category (hard floor, hard ratio, review floor, review ratio, issue type).
LENGTH_POLICY = {
    "badge_micro_1c": (4, 0.0, 6, 0.0, "compact_mapping_missing"),
    "badge_micro_2c": (6, 0.0, 8, 0.0, "compact_mapping_missing"),
    "label_generic_short": (8, 0.0, 10, 2.5, "length_overflow"),
    "title_name_short": (10, 0.0, 12, 2.5, "length_overflow"),
    "promo_short": (10, 0.0, 12, 2.6, "length_overflow"),
    "item_skill_name": (10, 2.6, 12, 3.0, "length_overflow"),
    "slogan_long": (10, 2.6, 12, 3.2, "headline_budget_overflow"),
    "other_review": (10, 0.0, 14, 2.6, "length_overflow"),
}
# Term lists of the UI-art classifier.
PROMO_PACK = ("自选箱", "自选礼包", "礼包")
PROMO = ("首充", "充值", "返利", "特惠", "福利", "礼包", "赠礼", "奖励预览", "热销", "折扣", "直购", "优惠")
BADGE_2C = ("热销", "特惠", "首充", "推荐", "限定", "新品", "极品", "福利", "赠礼", "胜利", "失败")
GENERIC_LABELS = ("挑战", "排行", "排行榜", "榜单", "商店", "支援", "胜", "败", "域", "图鉴", "重生", "兑换", "修罗模式", "设置", "奖励", "时装", "头像框", "秘卷", "战令")
ITEM_SKILL = ("之", "术", "卷", "刃", "玉", "魂", "符", "奥义", "查克拉", "元素", "战魂", "套装", "勾玉", "通灵")
SLOGAN_MARKS = ("，", "。", "！", "？", "：", "；", "、", "…")
DICT_ONLY = ("badge_micro_1c", "badge_micro_2c")
PROMO_HEADS = ("奖励预览", "充值返利", "今日充值")
# Approved compact terms.
PROMO_EXACT = {"奖励预览": "Нагр.", "充值返利": "Донат+", "今日充值": "Донат дня", "自选箱": "Пак", "自选礼包": "Пак"}
COMPACT_TERMS = {
    "奖励": "Награды", "时装": "Скин", "头像框": "Рамка", "战令": "БП", "十连": "x10", "单抽": "x1", "榜单": "Топ", "设置": "Настр.",
    "折扣": "Скидка", "热销": "Хит", "秘卷": "Свиток", "挑战": "Чел.", "排行": "Топ", "排行榜": "Топ", "商店": "Шоп", "支援": "Сапп.",
    "胜": "Поб.", "败": "Пор.", "域": "Зона", "图鉴": "Кодекс", "重生": "Рес.", "兑换": "Обм.", "修罗模式": "Асура", "充值": "Донат",
    "返利": "Бонус", "特惠": "Спец.", "福利": "Бонус", "礼包": "Пак", "赠礼": "Дар", "推荐": "Топ", "极品": "Эпик", "首充": "1-й дон.",
    "限定": "Лимит", "新品": "Нов.", "仙之试炼": "Сэн-тест", "仙人之力": "Сила Сэн.", "仙术铭刻": "Сэн-печ.", "仙术印记": "Сэн-знак",
    "人间道·灵魂吞噬": "Люд. путь·Погл. душ", **PROMO_EXACT,
}
# Keyword rules of the module tagger, in the order that settles ties.
TAG_KEYWORDS = {
    "skill_desc": ("技能", "攻击", "伤害", "效果", "持续", "回合", "暴击", "治疗", "概率"),
    "item_desc": ("道具", "装备", "获得", "消耗", "碎片", "材料", "合成"),
    "system_notice": ("已", "不可", "请", "警告", "提示", "确认", "错误", "失败", "成功"),
    "ui_button": ("确定", "取消", "返回", "领取", "购买", "前往", "开始"),
}
TAG_PREFIXES = {
    "ui_button": ("BTN_", "BUTTON_", "UI_BTN"),
    "ui_label": ("UI_", "LABEL_", "TXT_"),
    "skill_desc": ("SKILL_", "ABILITY_", "SPELL_"),
    "item_desc": ("ITEM_", "EQUIP_", "MATERIAL_"),
    "dialogue": ("DIALOG_", "NPC_", "STORY_", "QUEST_"),
    "system_notice": ("SYS_", "MSG_", "NOTICE_", "ERROR_"),
}
# Stratum and bucket patterns.
STRATUM_PLACEHOLDER = "\\{[^}]+\\}|%[sd]|⟦PH_[0-9]+⟧"
STRATUM_SYSTEM = "注意|禁止|必须|不可|提示|说明|警告|错误|失败|系统"
BUCKET_PLACEHOLDER = STRATUM_PLACEHOLDER + "|\\[.*?\\]|<[^>]+>|\\\\n"
BUCKET_SYSTEM = "注意|禁止|必须|不可|提示|说明|警告|错误|失败"
BUCKET_ADVERSARIAL = "[\"'\\\\/{}\\[\\]:@#]|https?://|[\\x{1F600}-\\x{1F64F}]|[!?]{2,}|\\.{3,}"
STRATA = ("UI", "Dialogue", "System", "Placeholder", "Other")
# Content classes by module substring, in order.
CONTENT_CLASSES = {
    "ui_button": "button|tab|menu",
    "payment": "payment|billing|shop|charge|currency",
    "system": "system|error|notice|warning|tutorial",
    "dialogue": "dialog|dialogue",
    "narrative": "story|narrative|quest|cutscene",
    "proper_noun": "character|npc|name|proper|place",
    "live_ops": "event|live|activity|season",
}
HIGH_RISK = ("ui_button", "payment", "system", "proper_noun")
HARD_DELTAS = ("term_removed", "banned_term_changed", "prohibited_alias_changed", "style_contract_changed", "placeholder_policy_changed")
RETRANSLATE_DELTAS = ("rubric_gate_changed", "risk_class_changed", "text_diff")
REFRESH_DELTAS = ("term_added", "term_changed", "preferred_term_changed")
# Length expansion by content type (multiplier, most letters).
LENGTH_RULES = {
    "ui_button": (3.5, 20), "ui_menu": (3.2, 30), "ui_label": (3.0, 40), "dialogue": (2.8, 150), "narrative": (2.5, 300),
    "system_message": (3.0, 100), "skill_description": (2.8, 200), "item_description": (2.8, 180), "tutorial": (2.6, 250), "glossary_term": (4.0, 25),
}
LENGTH_DEFAULT = (3.0, 5, 500)
# Forbidden output patterns, first match counts.
FORBIDDEN = ("[\\x{4e00}-\\x{9fff}]", "⟦PH_[^0-9]", "⟦TAG_[^0-9]", "\\s{4,}", "\\[待翻译\\]", "\\[TBD\\]", "\\[TODO\\]", "TODO", "FIXME", "\\[机器翻译\\]", "\\[MT\\]", "\\[To be translated\\]", "\\[Translation needed\\]", "TBD", "PLACEHOLDER", "\\x{fffd}", "[\\x{200b}\\x{200c}\\x{200d}\\x{feff}]")
TAG_FAMILIES = {"color": (("<color", "<c"), ("</color", "</c")), "bold": (("<b>",), ("</b>",)), "italic": (("<i>",), ("</i>",)), "size": (("<size",), ("</size>",))}
SELF_CLOSING = "br|img|hr|meta|input|base|link"
SEVERITY_RANK = {"minor": 1, "warning": 1, "major": 2, "critical": 3}
SCOPE_RANK = {"project": 4, "ip": 3, "genre": 2, "base": 1}
DECISIONS = {
    "accepted": "approve", "approve": "approve", "rejected": "reject", "reject": "reject", "revised": "request_retranslate",
    "request_retranslate": "request_retranslate", "request_refresh": "request_refresh", "ignore": "ignore", "supersede": "supersede",
}
REVIEW_STATES = ("pending", "acknowledged", "in_review", "approved", "rejected", "superseded", "closed")
TASK_BUCKETS = {
    "needs_user_action": "needs_your_action", "queued": "running", "running": "running", "needs_operator_review": "waiting_on_ops",
    "ready_for_download": "ready_to_collect", "failed": "failed", "draft": "running",
}
