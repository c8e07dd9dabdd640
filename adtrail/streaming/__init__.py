"""adtrail.streaming"""
