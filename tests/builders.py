"""Synthetic catalogs, folders and files."""

from __future__ import annotations

import json
from pathlib import Path

# The type names that tests name explicitly.
BASES = {
    1: "01.Ly_lich_nguoi_xin_vao_dang",
    2: "02.Don_xin_vao_dang",
    4: "04.Phieu_bo_sung_ho_so_dang_vien",
    5: "05.Quyet_dinh_ket_nap_dang_vien",
    55: "55.Giay_gioi_thieu_sinh_hoat_dang_tam_thoi",
}


def entries() -> list[dict]:
    made = []
    for n in range(1, 105):
        code = f"{n:02d}"
        base = BASES.get(n, f"{code}.Loai_{n}")
        made.append({"id": code, "name_vi": f"Loại {n}", "filename_base": base, "priority": 1 if n <= 2 else 3})
    return made


def write_catalog(path: Path, rows: list | None = None) -> str:
    path.write_text(json.dumps({"document_types": entries() if rows is None else rows}), encoding="utf-8")
    return str(path)


def pdf(path: Path, pages: int = 1, text: str = "") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "".join(f"{n + 2} 0 obj\n<< /Type /Page /Parent 1 0 R >>\nendobj\n" for n in range(pages))
    path.write_bytes(f"%PDF-1.4\n1 0 obj\n<< /Type /Pages /Count {pages} >>\nendobj\n{body}% {text}\n%%EOF\n".encode())
    return path


def junk(path: Path) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"not a pdf")
    return path


#: An archive of a few situations: folder name, and what it holds as (type number or file name, sequence, kind of file).
ARCHIVE = {
    "tidy": ("11.204.7.88.3_A7F2_Mai_Quynh_Chi", [(1, None, "first"), (2, None, "second")]),
    "series": ("11.204.7.88.4_B019_Ta_Hoai_Nam", [(55, 1, "sheet 1"), (55, 2, "sheet 2"), (55, 3, "sheet 3")]),
    "copies": ("11.204.9.12.5_C310_Luong_Gia_Bao", [(2, None, "same"), (2, 1, "same"), (2, 2, "same")]),
    "foreign": ("12.205.1.40.6_D777_Kieu_My_Linh", [("640.ghi_chep.pdf", None, "odd"), (4, None, "fourth")]),
    "spoilt": ("12.205.1.40.7_E004_Cao_Duc_Huy", [(1, None, None), (5, None, "fifth")]),
    "loose": ("hop chua phan loai", [("scan0001.pdf", None, "loose")]),
    "bare": ("12.205.2.41.8_F555_Ha_Thu_Uyen", []),
}


def archive(root: Path) -> dict[str, Path]:
    """Writes ARCHIVE; a file without content is no PDF."""
    for folder, files in ARCHIVE.values():
        (root / folder).mkdir(parents=True)
        for what, number, content in files:
            name = what if isinstance(what, str) else BASES[what] + (f".{number}" if number else "") + ".pdf"
            path = root / folder / name
            junk(path) if content is None else pdf(path, text=content)
    return {key: root / folder for key, (folder, _) in ARCHIVE.items()}


def numbered_cases(root: Path, count: int) -> None:
    """Cases with one document each, named by their number."""
    for n in range(count):
        pdf(root / f"7.1.2.{n % 7}.{n}_Z{n:06d}_Ho_so_so_{n}" / (BASES[1] + ".pdf"))
