"""Default word lists. All of them are parameters of the operators that use them."""

# Brand words. One-letter words are left out, they match nearly any text.
APPLE_WORDS = ["애플", "아이폰", "프로", "미니", "맥스", "플러스", "프맥", "잡스", "시리", "pro"]
SAMSUNG_WORDS = ["삼성", "갤럭시", "노트", "울트라", "폴드", "플립", "s24", "s23", "빅스비"]

# Sentiment words.
POSITIVE_WORDS = ["좋아요", "만족", "최고", "훌륭", "추천", "완벽"]
NEGATIVE_WORDS = ["별로", "실망", "부족", "최악", "문제", "불만"]

# Stop words of review cleaning.
REVIEW_STOPWORDS = ["잘", "너무", "정말", "매우"]

# Topics and their feature keywords.
TOPIC_KEYWORDS = {
    "영상 제작": ["화질", "안정감", "음질", "속도", "배터리", "저장 공간", "편집"],
    "사진 촬영": ["해상도", "렌즈", "밝기", "색감", "초점", "필터", "손떨림"],
    "디지털 아트": ["터치", "색상", "부드러움", "성능", "펜", "정밀함", "앱"],
    "음악 & 사운드": ["스피커", "마이크", "노이즈", "베이스", "연결성", "편집", "저장"],
    "쇼핑 & 패션": ["화면", "결제", "색감", "가상", "검색", "리뷰", "추천"],
    "SNS & 커뮤니티": ["카메라", "공유", "필터", "영상", "알림", "댓글", "트렌드"],
    "여행 & 탐방": ["위치", "지도", "배터리", "카메라", "검색", "길찾기", "번역"],
    "모바일 게임": ["반응속도", "화면", "성능", "발열", "몰입감", "조직감", "네트워크"],
    "독서 & 필기": ["화면", "필기감", "배터리", "무게", "관리", "가독성", "저장"],
    "운동 & 건강": ["추적", "심박수", "방수", "연동", "지속력", "센서", "데이터"],
}

# Class names of the sentiment scorer, in score order.
SENTIMENT_LABELS = ["negative", "neutral", "positive"]

# Items and the channel left out of collection.
TARGET_ITEMS = ["S24", "아이폰16"]
EXCLUDED_CHANNELS = ["보겸TV"]
