"""Labels, date formatting, rounding, ASCII folding and null handling."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.names import strip_space

# Display labels of the stored codes.
STATUS_LABELS = {
    "CHO_XAC_MINH": "Chờ xác minh",
    "DU_TAI_LIEU": "Đủ tài liệu",
    "CO_TAI_LIEU": "Có tài liệu",
    "KHONG_PHAT_SINH": "Không phát sinh",
    "CHUA_XAC_DINH": "Chưa xác định",
    "CAN_BO_SUNG": "Cần bổ sung",
    "CHO_KIEM_TRA": "Chờ kiểm tra",
    "DANG_SO_HOA": "Đang số hóa",
    "CHUA_XU_LY": "Chưa xử lý",
    "HOAN_THANH": "Hoàn thành",
    "CAN_XAC_MINH": "Cần xác minh",
    "REVIEW_PENDING": "Chờ rà soát",
    "REVIEW_REQUIRED": "Cần rà soát",
    "PROCESSED": "Đã xử lý",
    "FAILED": "Xử lý lỗi",
    "NEW": "Mới",
    "STALE_ANALYSIS": "Cần phân tích lại",
    "ANALYZED_PENDING_APPLY": "Đã phân tích, chờ áp dụng",
    "ACCEPT": "Chấp nhận",
    "KEEP_EXISTING": "Giữ nguyên",
    "MANUAL_FIX": "Sửa thủ công",
    "APPROVED": "Đã duyệt",
    "REJECTED": "Từ chối",
    "PENDING": "Đang chờ",
    "SUCCESS": "Thành công",
    "ERROR": "Lỗi",
    "RUNNING": "Đang chạy",
}
PARSE_STATUS_LABELS = {
    "OK": "Hợp lệ",
    "MALFORMED_NAME": "Tên tệp không chuẩn",
    "FILE_NGOAI_TAXONOMY": "Ngoài danh mục chuẩn",
    "FILE_KHONG_DOC_DUOC": "Không đọc được tệp",
    "FILE_BI_THIEU": "Tệp bị thiếu",
    "ERROR": "Lỗi phân tích",
}
WARNING_TYPE_LABELS = {
    "SAI_TEN_THU_MUC": "Sai tên thư mục",
    "SAI_TEN_FILE": "Sai tên tệp",
    "FILE_NGOAI_TAXONOMY": "Ngoài danh mục chuẩn",
    "TRUNG_TAI_LIEU": "Trùng lặp tài liệu",
    "FILE_KHONG_DOC_DUOC": "Không đọc được tệp",
    "CHANGED_AFTER_COMPLETION": "Thay đổi sau khi hoàn thành",
    "REVIEW_PENDING": "Chờ rà soát",
    "CAN_XAC_MINH": "Cần xác minh",
}
EVENT_TYPE_LABELS = {
    "AUTO_STATUS_CHANGED": "Tự động cập nhật trạng thái",
    "MANUAL_STATUS_CHANGED": "Chỉnh sửa trạng thái thủ công",
    "CHECKLIST_OVERRIDE": "Điều chỉnh checklist",
    "MARK_COMPLETED": "Đánh dấu hoàn thành",
    "REOPENED": "Mở lại hồ sơ",
    "NOTE_UPDATED": "Cập nhật ghi chú",
    "DOCUMENT_ADDED": "Thêm tài liệu mới",
}
BOOLEAN_LABELS = {
    "true": "Có",
    "false": "Không",
    "1": "Có",
    "0": "Không",
    "yes": "Có",
    "no": "Không",
}
UNDETERMINED = "Chưa xác định"
NOT_SCANNED = "Chưa quét"
NO_DATE = "—"

# On a clash the later table wins.
LABELS = {
    **STATUS_LABELS,
    **PARSE_STATUS_LABELS,
    **WARNING_TYPE_LABELS,
    **EVENT_TYPE_LABELS,
    **BOOLEAN_LABELS,
}


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def ui_label(value: Column, fallback: str | None = None) -> Column:
    """Display label of a code; unknown codes fall back, other text stays as it is."""
    text = strip_space(value.cast("string"))
    unknown_code = (F.upper(text) == text) & (F.lower(text) != text) & text.contains("_")
    return (
        F.when(value.isNull(), F.lit(fallback or UNDETERMINED))
        .when(text == "", F.lit(fallback or ""))
        .otherwise(
            F.coalesce(
                _lookup(LABELS, text),
                _lookup(BOOLEAN_LABELS, F.lower(text)),
                F.when(unknown_code, F.lit(fallback or UNDETERMINED)),
                text,
            )
        )
    )


# Every form of ISO 8601 that the fixed input format allows: calendar and week dates, with and without separators, any one
# character between date and time, times down to the hour, fractions after a point or a comma, and offsets likewise.
_CLOCK = r"(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,]\d+)?)?|(\d{2})(?:(\d{2})(?:[.,]\d+)?)?)?"
_ISO = (
    r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})"
    r"|(\d{4})-W(\d{2})(?:-(\d)(?!\d))?|(\d{4})W(\d{2})(?:(\d)(?!\d)|(\d)(?=\d(?:\d\d)*(?!\d)))?)"
    rf"(?:(?s:.){_CLOCK}(?:[+-]{_CLOCK})?)?\z"
)


def _week_date(year: Column, week: Column, day: Column) -> Column:
    """The date of an ISO week and day (1 to 7); null if the year has no such week or the day is out of range."""
    fourth = F.when(year >= 1, F.make_date(year, F.lit(1), F.lit(4)))  # always in week 1

    def of(monday: Column) -> Column:
        found = F.date_add(monday, (week - 1) * 7 + day - 1)
        fine = week.between(1, 52) | ((week == 53) & (F.weekofyear(F.date_add(monday, 52 * 7)) == 53))
        return F.when(fine & day.between(1, 7) & F.year(found).between(1, 9999), found)

    return _once(F.date_sub(fourth, F.weekday(fourth)), of)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shown_datetime(parts: Column) -> Column:
    """``dd/MM/yyyy HH:mm`` from the groups of the pattern (empty where they hold nothing); null if out of range."""

    def group(*numbers: int) -> Column:
        return F.concat(*[F.get(parts, F.lit(n - 1)) for n in numbers])

    number = lambda *numbers: group(*numbers).try_cast("int")
    zero = lambda *numbers: F.coalesce(number(*numbers), F.lit(0))
    calendar = F.try_to_date(F.concat_ws("-", group(1, 4), group(2, 5), group(3, 6)), "yyyy-MM-dd")
    by_week = _week_date(number(7, 10), number(8, 11), F.coalesce(number(9, 12, 13), F.lit(1)))
    date = F.when(group(8, 11) != "", by_week).otherwise(calendar)
    offset = zero(19) * 3600 + zero(20, 22) * 60 + zero(21, 23)
    fine = (number(1, 4, 7, 10) >= 1) & (zero(14) <= 23) & (zero(15, 17) <= 59) & (zero(16, 18) <= 59) & (offset < 24 * 3600)
    clock = F.concat_ws(":", F.lpad(group(14), 2, "0"), F.lpad(group(15, 17), 2, "0"))
    return F.concat(F.date_format(F.when(fine, date), "dd/MM/yyyy"), F.lit(" "), clock)


def format_datetime(value: Column, fallback: str = NOT_SCANNED) -> Column:
    """ISO text to ``dd/MM/yyyy HH:mm`` at the written offset; unreadable text is kept."""

    def shown(text: Column) -> Column:
        iso = F.replace(text, F.lit("Z"), F.lit("+00:00"))
        groups = ",".join(f"${n}" for n in range(1, 24))
        parts = F.when(iso.rlike(_ISO), F.split(F.regexp_replace(iso, _ISO, groups), ","))
        return F.coalesce(_once(parts, _shown_datetime), text)

    return F.when(value.isNull() | (value == ""), F.lit(fallback)).otherwise(_once(strip_space(value), shown))


def format_date(value: Column, fallback: str = NO_DATE) -> Column:
    """First ten characters as ``dd/MM/yyyy``; unreadable text is kept."""
    text = strip_space(value)
    head = F.substring(text, 1, 10)
    parsed = F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(head, "yyyy-M-d"))
    return (
        F.when(value.isNull() | (value == ""), F.lit(fallback))
        .otherwise(F.coalesce(F.date_format(parsed, "dd/MM/yyyy"), text))
    )


def or_else(value: Column, fallback: Column | str) -> Column:
    """First non-null and non-empty value."""
    other = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.coalesce(F.nullif(value, F.lit("")), other)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; other letters keep their case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ascii_like(text: Column, query: str) -> Column:
    """``%query%`` with ASCII-only case folding; ``%`` and ``_`` in the query stay wildcards."""
    folded = "".join(c.lower() if c in string.ascii_uppercase else c for c in query)
    return ascii_lower(text).like("%" + folded.replace("\\", "\\\\") + "%")


def _hundredths(part: Column, whole: Column) -> Column:
    """``part / whole`` of two integers in hundredths, the exact quotient rounded half-even."""
    whole_units = F.call_function("div", part, whole)
    rest = F.pmod(part, whole)
    up = (rest * 2 > whole) | ((rest * 2 == whole) & (whole_units % 2 == 1))
    return (whole_units + F.when(up, 1).otherwise(0)).cast("double") / 100.0


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, half-even to two decimals; 0.0 of nothing.

    Integer arithmetic: rounding a binary quotient would be off by 0.01 near some ties.
    """
    exact = _hundredths(part.cast("bigint") * 10_000, F.nullif(whole.cast("bigint"), F.lit(0)))
    return F.when(whole == 0, F.lit(0.0)).otherwise(exact)


def mean2(total: Column, count: Column) -> Column:
    """Mean of two-decimal values given their decimal sum, half-even to two decimals; 0.0 of
    nothing."""
    exact = _hundredths((total * 100).cast("bigint"), F.nullif(count.cast("bigint"), F.lit(0)))
    return F.when(count == 0, F.lit(0.0)).otherwise(exact)


def priority_weight(priority: Column) -> Column:
    return F.when(priority == 1, 3).when(priority == 2, 2).otherwise(1)


def fingerprint(case_key: Column, subject: Column, kind: Column, message: Column) -> Column:
    """``case:subject:kind:message``; a missing subject counts as 0."""
    return F.concat_ws(
        ":",
        F.coalesce(case_key, F.lit("")),
        F.coalesce(subject, F.lit("0")),
        F.coalesce(kind, F.lit("")),
        F.coalesce(message, F.lit("")),
    )


def override_detail(code: Column, old: Column, new: Column) -> Column:
    return F.concat(code, F.lit(": "), F.coalesce(old, F.lit("None")), F.lit(" -> "), new)


def iso_micros(ts: Column) -> Column:
    """UTC ISO text with microseconds."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def reopen_detail(completed_at: Column, reviewed_by: Column) -> Column:
    """Audit text naming the former completion; null if the case was never completed.

    The words are fixed values of the audit trail.
    """
    return F.when(
        completed_at.isNotNull(),
        F.concat(
            F.lit("Hồ sơ từng được đánh dấu hoàn thành lúc "),
            iso_micros(completed_at),
            F.lit(" bởi "),
            or_else(reviewed_by, "không xác định"),
            F.lit("."),
        ),
    )


def valid_rotation(rotation: Column) -> Column:
    return F.pmod(F.coalesce(rotation, F.lit(0)), F.lit(360)).isin(0, 90, 180, 270)


def allowed_upload(name: Column) -> Column:
    """True for names ending in one of the accepted upload extensions."""
    extension = F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))
    return F.coalesce(extension.isin(".jpg", ".jpeg", ".png", ".pdf"), F.lit(False))
