"""Published step counts and mart results of the original
study (full analysis window). Used to replay pre-counted input through the
mart functions and compare every derived column (relative tolerance 1e-9).
"""

# (funnel_type, unit_type, step_order, funnel_step, reached_count,
#  step_conversion_rate, overall_conversion_rate, dropoff_count, dropoff_rate)
SUMMARY = [
    ("Checkout Friction Funnel", "Sessions", 1, "Begin Checkout", 11106, 1.0, 1.0, 0, 0.0),
    ("Checkout Friction Funnel", "Sessions", 2, "Add Shipping Info", 7081, 0.63758328831262379, 0.63758328831262379, 4025, 0.36241671168737621),
    ("Checkout Friction Funnel", "Sessions", 3, "Add Payment Info", 4677, 0.66049992938850444, 0.42112371690977851, 2404, 0.33950007061149556),
    ("Checkout Friction Funnel", "Sessions", 4, "Purchase", 3291, 0.70365618986529832, 0.29632631010264721, 1386, 0.29634381013470168),
    ("Session-Level Main Funnel", "Sessions", 1, "View Item", 77020, 1.0, 1.0, 0, 0.0),
    ("Session-Level Main Funnel", "Sessions", 2, "Add to Cart", 15167, 0.19692287717475981, 0.19692287717475981, 61853, 0.80307712282524024),
    ("Session-Level Main Funnel", "Sessions", 3, "Begin Checkout", 5416, 0.35709105294389132, 0.070319397559075569, 9751, 0.64290894705610868),
    ("Session-Level Main Funnel", "Sessions", 4, "Purchase", 2834, 0.52326440177252587, 0.036795637496754088, 2582, 0.47673559822747413),
    ("User-Level Main Funnel", "Users", 1, "View Item", 61252, 1.0, 1.0, 0, 0.0),
    ("User-Level Main Funnel", "Users", 2, "Add to Cart", 12538, 0.20469535688630575, 0.20469535688630575, 48714, 0.79530464311369431),
    ("User-Level Main Funnel", "Users", 3, "Begin Checkout", 5034, 0.40149944169724039, 0.082185071507869134, 7504, 0.59850055830275961),
    ("User-Level Main Funnel", "Users", 4, "Purchase", 2856, 0.567342073897497, 0.046627048912688568, 2178, 0.432657926102503),
]

# unique_transactions, total_purchase_revenue, average_order_value
BASELINE = (4452, 309198.0, 69.451482479784374)

# (funnel_type, step_order, funnel_transition, estimated_revenue_leakage,
#  leakage_rank_within_funnel, overall_leakage_rank, leakage_priority)
LEAKAGE = [
    ("Session-Level Main Funnel", 2, "View Item → Add to Cart", 4295782.5458221026, 1, 1, "Very High"),
    ("User-Level Main Funnel", 2, "View Item → Add to Cart", 3383259.5175202158, 1, 2, "Very High"),
    ("Session-Level Main Funnel", 3, "Add to Cart → Begin Checkout", 677221.40566037747, 2, 3, "High"),
    ("User-Level Main Funnel", 3, "Add to Cart → Begin Checkout", 521163.92452830193, 2, 4, "High"),
    ("Checkout Friction Funnel", 2, "Begin Checkout → Add Shipping Info", 279542.21698113211, 1, 5, "Medium"),
    ("Session-Level Main Funnel", 4, "Begin Checkout → Purchase", 179323.72776280326, 3, 6, "Medium"),
    ("Checkout Friction Funnel", 3, "Add Shipping Info → Add Payment Info", 166961.36388140163, 2, 7, "Medium"),
    ("User-Level Main Funnel", 4, "Begin Checkout → Purchase", 151265.32884097038, 3, 8, "Medium"),
    ("Checkout Friction Funnel", 4, "Add Payment Info → Purchase", 96259.754716981144, 3, 9, "Low"),
]

# (funnel_type, step_order, normalized_revenue_leakage, friction_score,
#  overall_friction_rank, friction_rank_within_funnel, friction_priority, likely_business_issue)
FRICTION = [
    ("Session-Level Main Funnel", 2, 1.0, 93.11, 1, 1, "Critical", "Product page / merchandising friction"),
    ("User-Level Main Funnel", 2, 0.787576997073707, 79.03, 2, 1, "Critical", "Product page / merchandising friction"),
    ("Session-Level Main Funnel", 3, 0.15764797180411619, 32.75, 3, 2, "Medium", "Cart-to-checkout friction"),
    ("User-Level Main Funnel", 3, 0.12131990364250722, 28.83, 4, 2, "Medium", "Cart-to-checkout friction"),
    ("Session-Level Main Funnel", 4, 0.041744135288506616, 19.4, 5, 3, "Low", "Checkout completion friction"),
    ("User-Level Main Funnel", 4, 0.035212520007113633, 17.43, 6, 3, "Low", "Checkout completion friction"),
    ("Checkout Friction Funnel", 2, 0.065073642345561247, 16.91, 7, 1, "Low", "Checkout start / shipping friction"),
    ("Checkout Friction Funnel", 3, 0.038866344397199812, 14.41, 8, 2, "Low", "Shipping-to-payment friction"),
    ("Checkout Friction Funnel", 4, 0.022407967277254134, 11.83, 9, 3, "Low", "Payment confirmation friction"),
]

# (category, sessions, users, viewed, carted, checkout, purchased, total_item_revenue,
#  purchased_item_rows, view_to_cart_rate, checkout_to_purchase_rate,
#  revenue_per_purchasing_session, is_high_volume, is_low_confidence)
CATEGORY = [
    ("Apparel", 30790, 24902, 30790, 8212, 1844, 1144, 172597.0, 5211, 0.26670997076973041, 0.62039045553145333, 150.87150349650349, True, False),
    ("Other", 25544, 21850, 25544, 5414, 1899, 1168, 140995.0, 8844, 0.21194801127466334, 0.61506055818852023, 120.71489726027397, True, True),
    ("Sale", 9763, 7973, 9763, 2838, 0, 0, None, None, 0.29068933729386459, None, None, True, True),
    ("Stationery", 5949, 5330, 5949, 1820, 152, 92, 1532.0, 305, 0.30593377038157671, 0.60526315789473684, 16.652173913043477, True, False),
    ("Drinkware", 5382, 4563, 5382, 1518, 291, 212, 15807.0, 709, 0.28205128205128205, 0.72852233676975942, 74.561320754716988, True, False),
    ("Unknown", 4986, 4638, 4986, 909, 21, 16, 7319.0, 230, 0.18231046931407943, 0.76190476190476186, 457.4375, True, True),
    ("Bags", 4805, 4270, 4805, 844, 299, 169, 23860.0, 704, 0.17565036420395422, 0.56521739130434778, 141.18343195266272, True, False),
]

# (channel, device, sessions, users, viewed, carted, checkout, purchased,
#  view_to_cart_rate, checkout_to_purchase_dropoff_rate, is_high_volume_segment)
SEGMENTS = [
    ("Google Organic", "desktop", 13695, 12945, 13695, 2463, 820, 403, 0.17984665936473165, 0.50853658536585367, True),
    ("Direct", "desktop", 10402, 9750, 10402, 2081, 720, 358, 0.20005768121515094, 0.50277777777777777, True),
    ("Google Organic", "mobile", 9451, 8925, 9451, 1780, 614, 321, 0.18833985821606181, 0.4771986970684039, True),
    ("Referral", "desktop", 8172, 7452, 8172, 1661, 623, 341, 0.2032550171316691, 0.4526484751203852, True),
    ("Other", "desktop", 7328, 7218, 7328, 1399, 468, 213, 0.19091157205240175, 0.54487179487179493, True),
    ("Direct", "mobile", 6910, 6524, 6910, 1358, 503, 270, 0.19652677279305356, 0.463220675944334, True),
    ("Referral", "mobile", 5604, 5149, 5604, 1190, 438, 254, 0.21234832262669523, 0.42009132420091322, True),
    ("Other", "mobile", 5024, 4936, 5024, 917, 310, 140, 0.18252388535031847, 0.54838709677419351, True),
    ("Data Deleted / Unknown", "desktop", 3346, 2944, 3346, 841, 368, 225, 0.25134488942020322, 0.38858695652173914, True),
    ("Data Deleted / Unknown", "mobile", 2296, 2048, 2296, 608, 262, 160, 0.26480836236933797, 0.38931297709923662, True),
    ("Google CPC", "desktop", 1876, 1868, 1876, 331, 110, 61, 0.17643923240938167, 0.44545454545454544, True),
    ("Google CPC", "mobile", 1216, 1214, 1216, 217, 67, 27, 0.17845394736842105, 0.59701492537313428, True),
    ("Google Organic", "tablet", 517, 494, 517, 96, 31, 12, 0.18568665377176016, 0.61290322580645162, False),
    ("Direct", "tablet", 366, 351, 366, 66, 25, 15, 0.18032786885245902, 0.4, False),
    ("Other", "tablet", 315, 312, 315, 59, 16, 8, 0.1873015873015873, 0.5, False),
    ("Referral", "tablet", 314, 292, 314, 63, 22, 14, 0.20063694267515925, 0.36363636363636365, False),
    ("Data Deleted / Unknown", "tablet", 113, 107, 113, 21, 12, 9, 0.18584070796460178, 0.25, False),
    ("Google CPC", "tablet", 75, 75, 75, 16, 7, 3, 0.21333333333333335, 0.5714285714285714, False),
]
