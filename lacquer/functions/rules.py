"""First-match rules and predicates on landed pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a title contains and the event it then reports, first match wins.
EVENT_RULES = (
    ("báo cáo tài chính", "financial_statement"),
    ("tái lập báo cáo tài chính", "financial_statement"),
    ("đại hội đồng cổ đông", "agm"),
    ("nghị quyết hội đồng quản trị", "board_resolution"),
    ("nghị quyết hđqt", "board_resolution"),
    ("phát hành thêm cổ phiếu", "stock_issuance"),
    ("phát hành cổ phiếu", "stock_issuance"),
    ("tăng vốn điều lệ", "stock_issuance"),
    ("chia cổ phiếu", "stock_split"),
    ("stock split", "stock_split"),
    ("phát hành quyền mua", "rights_issue"),
    ("quyền mua cổ phiếu", "rights_issue"),
    ("chốt danh sách cổ đông", "shareholder_change"),
    ("lập danh sách cổ đông", "shareholder_change"),
    ("thay đổi cổ đông lớn", "shareholder_change"),
    ("giao dịch cổ đông", "insider_trading"),
    ("công bố thông tin giao dịch", "insider_trading"),
    ("sáp nhập", "ma"),
    ("hợp nhất", "ma"),
    ("mua lại doanh nghiệp", "ma"),
    ("mua lại công ty", "ma"),
    ("bổ nhiệm", "exec_change"),
    ("bãi nhiệm", "exec_change"),
    ("thay đổi nhân sự", "exec_change"),
    ("esop", "esop"),
    ("sở hữu nước ngoài", "foreign_ownership"),
    ("room nước ngoài", "foreign_ownership"),
    ("trái phiếu", "bond_issuance"),
    ("coupon", "bond_issuance"),
    ("cổ tức", "dividend"),
    ("chi trả cổ tức", "dividend"),
    ("chia tiền mặt", "dividend"),
)
# The event types.
EVENT_TYPES = (
    "financial_statement", "board_resolution", "dividend", "stock_issuance", "stock_split", "rights_issue", "esop", "insider_trading",
    "shareholder_change", "ma", "exec_change", "agm", "bond_issuance", "foreign_ownership", "extraordinary_announcement", "other",
)
# Wordings of pages that block a reader.
BLOCKING_WORDS = (
    "verify you are human", "human verification", "are you a robot", "security check", "please verify",
    "unusual traffic", "access denied", "cloudflare", "challenge platform", "ray id",
)


def first_match(text: Column, rules: tuple[tuple[str, str], ...] = EVENT_RULES, default: str = "other") -> Column:
    """Value of the first rule whose wording the text contains, letter case aside."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for wording, value in rules:
        hit = F.contains(low, F.lit(wording))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default) if out is not None else F.lit(default)


def blocking_word(title: Column, content: Column, words: tuple[str, ...] = BLOCKING_WORDS) -> Column:
    """First of the words in the content or the title, null if none is."""
    low = F.lower(F.concat_ws("\n", content, title))
    return F.try_element_at(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)), F.lit(1))


def status_verdict(status: Column) -> Column:
    """blocked for 403, throttled for 429, broken for 500 and above, else ok."""
    return F.when(status == 403, "blocked").when(status == 429, "throttled").when(status >= 500, "broken").otherwise("ok")
