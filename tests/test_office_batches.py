import pandas as pd

from foliospark.sources import office
from testkit import archives


def test_few_extracted_files_are_held_at_a_time():
    """One incoming batch of many files goes on in parts; before, all of its texts were held at once."""
    made = [archives.docx_bytes([f"text {i}"], [], None, None) for i in range(2 * office.FILES_PER_BATCH + 1)]
    batch = pd.DataFrame({"path": [f"/d/{i}.docx" for i in range(len(made))], "content": made})
    parts = list(office._archive_job(office.docx_text, office.docx_properties)(iter([batch])))
    assert [len(p) for p in parts] == [office.FILES_PER_BATCH, office.FILES_PER_BATCH, 1]
    assert [t for p in parts for t in p["content"]] == [f"text {i}" for i in range(len(made))]
