"""Texts and defaults that results must carry unchanged."""

# Job parameters.
TOP_N = 5
EVENT_WINDOW = "5 seconds"
WATERMARK_DELAY = "5 seconds"
JSON_WINDOW = "10 seconds"
WORD_WINDOW = "10 seconds"
WORD_SLIDE = "5 seconds"
WORD_BUCKET = "3 seconds"
GLOBAL_WINDOW = "10 milliseconds"
SESSION_GAP = "10 seconds"
COUNT_WINDOW_ALL = 5
COUNT_WINDOW_SIZE = 5
COUNT_WINDOW_SLIDE = 2
ALERT_THRESHOLD = 100
ALERT_TIMES = 3
CHECKPOINT_INTERVAL = "1 second"
KEPT_WORD = "a"

# Texts.
SUFFIX = "aaaaa"
BREACH_MESSAGE = "dsadsad"
ALERT_SUFFIX = " 超过指定阈值 "
REPORT_RULE = "=" * 36
REPORT_TIME = "时间: "
# One report line: rank, client, sessions, c2s/s2c packets, c2s/s2c bytes, window end, order.
REPORT_LINE = (
    "No%s: \t客户端IP=%s \t会话次数=%s \tc2s包数=%s \ts2c包数%s"
    " \tc2s字节数=%s \ts2c字节数%s \t时间戳是 :%s \torerby：%s"
)
