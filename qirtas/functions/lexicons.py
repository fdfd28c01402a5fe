"""Word lists that take part in results."""

from __future__ import annotations

# The 50 words counted by f57_top50_words_count.
TOP_WORDS = tuple(
    """
    درس بحث علم جمع هدف حلل عمل جزير
    خدم اثر حقق فهم عزز فعل قدم ركز
    عبر ظهر دول تيج نتج وجد كشف طور
    استخدم اقترح قيس وصف فسر حدد اختبر
    قارن صمم بنى نفذ قيم ادار عالج حسن
    طبق وضح اثبت اكتشف فحص راجع لخص
    استنتج اقيس نمذج صنف
    """.split()
)

# The 20 words of the streaming rule classifier, which are the
# first 20 of the list above.
RULE_WORDS = TOP_WORDS[:20]
