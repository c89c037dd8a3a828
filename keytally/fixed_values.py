"""Fixed values.

These values must equal the reference's for the generated tables, feeds and
messages to have the reference's shape. They are stated here once, in the order the
reference lists them; every other module imports them from here.
"""

# --- FIXED VALUES (must equal the reference) ---------------------------------------

# Offline table sizes and id ranges.
USER_NUM = 100
PRODUCT_NUM = 100
SESSION_NUM = 10000
PAGE_NUM = 50
CATEGORY_NUM = 20
LOG_ABOUT_NUM = 100000

# Weighted options: (value, weight).
PROFESSIONS = [("学生", 40), ("程序员", 30), ("经理", 20), ("老师", 10)]
GENDERS = [("男", 60), ("女", 40)]
AGE_FROM = 10
AGE_TO = 59
PRODUCT_EXTEND_INFO = [("自营", 70), ("第三方", 30)]
SEARCH_KEYWORDS = [("手机", 30), ("笔记本", 70), ("内存", 70), ("i7", 70), ("苹果", 70), ("吃鸡", 70)]
ACTIONS = [("search", 20), ("click", 60), ("order", 6), ("pay", 4), ("quit", 10)]

# City dimension: (city_id, city_name, area).
CITIES = [
    (1, "北京", "华北"), (2, "上海", "华东"), (3, "深圳", "华南"), (4, "广州", "华南"),
    (5, "武汉", "华中"), (6, "南京", "华东"), (7, "天津", "华北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"), (10, "大连", "东北"), (11, "沈阳", "东北"), (12, "西安", "西北"),
    (13, "长沙", "华中"), (14, "重庆", "西南"), (15, "济南", "华东"), (16, "石家庄", "华北"),
    (17, "银川", "西北"), (18, "杭州", "华东"), (19, "保定", "华北"), (20, "福州", "华南"),
    (21, "贵阳", "西南"), (22, "青岛", "华东"), (23, "苏州", "华东"), (24, "郑州", "华北"),
    (25, "无锡", "华东"), (26, "厦门", "华南"),
]

# Label prefixes.
USERNAME_PREFIX = "user_"
NAME_PREFIX = "name_"
PRODUCT_NAME_PREFIX = "商品_"

# Event-time walk: start and end day (format yyyy-MM-dd).
WALK_START_DATE = "2019-11-26"
WALK_END_DATE = "2019-11-27"

# Ad-click feed: (city_name, area, weight); lines per batch; user and ad id ranges;
# pause between batches in seconds.
AD_CITIES = [("北京", "华北", 30), ("上海", "华东", 30), ("广州", "华南", 10),
             ("深圳", "华南", 20), ("天津", "华北", 10)]
AD_BATCH_SIZE = 51
AD_USER_FROM, AD_USER_TO = 1, 6
AD_ID_FROM, AD_ID_TO = 1, 6
AD_PAUSE_SECONDS = 2

# Record logs and stream jobs.
TOPIC = "wc"
AD_TOPIC = "test"
HASH_NAME = "wordcount"
GROUPS = ["bigdata2", "bigdata3", "bigdata4", "bigdata5"]
BATCH_INTERVAL = "3 seconds"
STARTING_OFFSETS = "earliest"
# Demo message body: the reference's wording except one name word, left out on purpose.
MESSAGE_TEMPLATE = "%d: this is a %d kafka data"
MESSAGE_COUNT = 10
MESSAGE_PAUSE_SECONDS = 0.5
LETTER_FROM, LETTER_TO = 97, 122
PRODUCER_ACKS = "all"
# Columns of the table of saved positions, and the names they have here.
POSITION_COLUMNS = {"groupId": "group_id", "topic": "topic", "partitionId": "partition",
                    "untilOffset": "until_offset"}

# --- end of fixed values -------------------------------------------------------------
