"""Closed vocabularies and thresholds.

Fixed values: results depend on them being as they are here; every operator takes them as
parameters.
"""

CARD_TYPES = ["事实", "流程", "决策", "禁忌", "运营"]
FRAME_LABELS = ["口内照", "X光", "PPT页", "人脸", "其他"]
OTHER_LABEL = "其他"
NO_SOURCE = "无"
NO_SOURCE_NOTE = "干扰项为概念近邻辨析,非临床错误断言"
NO_SOURCE_MARK = "概念近邻"
PENDING = "待审"

CARD_CONTENT = 8
QUOTE = (30, 150)
CARDS = 12
SEGMENT = 4000
FIXED = (500, 100)
SEMANTIC = (300, 700)
BM25 = (1.5, 0.75)
TITLE_MATCH = 0.55
LIVE_MATCH = 0.75
DURATION = 0.05
TOPICAL = 0.35
HASH_DISTANCE = 6
FRAME_STEP = 45.0
PAIR = (6, 0.12)
REVIEW = 8
GRAMS = (2, 6)
STEM, EXPLANATION = 8, 10
HANDOUT, MARKS, MARK_REACH = 500, 3, 5
#: minimum n-gram count, minimum cluster count, clusters kept, of each round
ROUNDS = [(3, 5, 300), (2, 3, 400), (2, 2, 500)]
ENOUGH_TERMS = 100
#: Characters of a context on each side; the kind of candidates that the dictionary anchors; what is suggested for these, and for others.
CONTEXT = 22
ANCHORED = "锚定"
SUGGEST = ("建议采纳(与词典术语同音异形)", "建议 LLM 裁决")

#: How speakers give their names, in the order they are tried; words that are no names; what a name never follows.
INTRODUCTIONS = [
    r"我是([\u4e00-\u9fff]{2,3})医生",
    r"我是[^,，。]{0,12}?的([\u4e00-\u9fff]{2,3})医生",
    r"创始人([\u4e00-\u9fff]{2,3})",
    r"我是([\u4e00-\u9fff]{2,3})[,，]",
]
NO_NAMES = ["大家", "各位", "老师", "孩子", "正畸", "一个", "一名"]
BEFORE_NO_NAME = "个名位"
#: Kinds of listed goods that are lessons, those of them that count as missing, and the kind of containers.
LESSON_KINDS = [3, 4, 50]
LISTED_KINDS = [3, 50]
CONTAINER_KIND = 7
