"""Fixed values and character classes shared by the operators.

The classes are spelled so that Java and RE2 read them the same way.
"""

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
#: The same characters, one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

HEADING_1_4 = rf"^(#{{1,4}})[{SPACE}]+([^\n]+)"
HEADING_1_6 = rf"^(#{{1,6}})[{SPACE}]+([^\n]+)"
LINK = r"\[([^\]]*)\]\(([^)]+)\)"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
TABLE_ROW = r"^\|[^\n]+\|$"
TABLE_SEPARATOR = rf"^\|[{SPACE}\-:]+\|$"

# Words that are keywords, and what names a business.
KEYWORD = "[A-Z]{2,}|[A-Za-z]+(?:システム|ツール)|[ァ-ヴー]{3,}"
BUSINESS = "([^、。]+(?:業務|処理|受付|管理|設計|運用))"

# Section titles.
OPENING = "（冒頭）"
SUMMARY_HEADING = "## サマリー"
TOC_HEADING = "## 目次"
SPECIAL_SECTIONS = ("サマリー", "目次", "概要", "Summary")
DEFAULT_MAJOR = "概要"

# Files of the base that are reports, not documents.
BASE_REPORTS = ("readme.md", "UPDATE_REPORT.md", "link_check_report.md")

# Page furniture lines (case-insensitive, matched at line start).
FURNITURE = (
    rf"^[{SPACE}]*\d+[{SPACE}]*$",
    rf"^[{SPACE}]*\d{{4}}[/\-年]\d{{1,2}}[/\-月]\d{{1,2}}日?[{SPACE}]*$",
    rf"^[{SPACE}]*(?:Copyright|©|All Rights Reserved)",
    rf"^[{SPACE}]*(?:Level|レベル)[{SPACE}]*[A-Za-z0-9][{SPACE}]*[:：]?",
    rf"^[{SPACE}]*全体目次へ[{SPACE}]*$",
    rf"^[{SPACE}]*WEB[{SPACE}]*機器交換",
    rf"^[{SPACE}]*ソリューション[{SPACE}]*[A-Z][{SPACE}]*$",
)

# Words that mark a described image as a diagram.
DIAGRAM_WORDS = (
    "フロー", "フローチャート", "プロセス", "ワークフロー",
    "図", "概念図", "構成図", "組織図", "階層図",
    "チャート", "タイムライン", "ダイアグラム",
    "矢印", "ボックス", "分岐", "処理",
)

# Lines about decorative images.
DECORATIVE = ("slide_001", "cover", "logo", "背景", "タイトルスライド", "表紙", "img_001_001", "装飾")

# Document information lines.
DOC_INFO = (
    r"抽出日時[：:][^\n]*",
    r"ファイル形式[：:][^\n]*",
    r"元ファイル名[：:][^\n]*",
    r"更新日[：:][^\n]*",
    r"作成日[：:][^\n]*",
    r"バージョン[：:][^\n]*",
    "改訂履歴",
    "更新履歴",
    "変更履歴",
)
REVISION_SECTION = rf"(?ms)(#{{1,3}}[{SPACE}]*(?:改訂|更新|変更)履歴.*?)(?=^#{{1,3}}[{SPACE}]|\z)"

# Labels of described figures and tables.
LABELS = (
    r"図の説明[：:]",
    r"表の説明[：:]",
    rf">[{SPACE}]*\*\*図の説明",
    rf">[{SPACE}]*\*\*表の説明",
)

# Thresholds of the content-loss checks.
CHAR_RATIO_OK = 0.85
CHAR_RATIO_ERROR = 0.60
UNEXPLAINED_OK = 0.05
TABLE_RATIO_OK = 0.80

# Extensions by kind.
EXT_CONVERTIBLE = (".pdf", ".xlsx", ".xlsm", ".docx")
EXT_LEGACY = (".xls", ".doc", ".ppt", ".pptx")
EXT_IMAGE = (".png", ".jpg", ".jpeg", ".tif", ".tiff")
EXT_EXCLUDED = (".lnk", ".db", ".mp4", ".ai", ".zip", ".tmp", ".svg")

# Parts of messages of errors that may pass.
TRANSIENT = (
    "429", "timeout", "timed out", "navigation",
    "target closed", "net::err", "connection reset", "socket",
)
